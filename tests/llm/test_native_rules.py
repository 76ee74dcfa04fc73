import re

from pyspark.sql import functions as F

from tidemark.llm import licenses, quality_rules as qr

from rows import SMALL, awkward_docs, awkward_texts


def base(text):
    """Places of the phrases by a plain scan."""
    t = "".join(c.lower() if c.isascii() else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    found = []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        found += [(k, label) for k in range(len(w) - len(p) + 1) if w[k:k + len(p)] == p]
    return (len(w), len(found), min(found)[0] if found else None, max(found)[0] if found else None,
            ",".join(sorted({x for _, x in found})))


LICENSED = [
    (30, "Apache License, version 2. CC-BY and cc by-nc 4.0; MIT  License mit license"), (31, "gnu general public"),
    (32, "x GNU General Public License GNU general public license"), (33, "cc"), (34, "cc by"), (35, "ccé by cc-by"),
    (36, "Permission is hereby granted, free of charge, to any person obtaining a copy of this new software and "
         "associated documentation files, to deal in the software without any restriction"),
    (37, "Redistribution and use in source and binary forms of the thing")]


def test_license_places(spark):
    rows = awkward_texts() + LICENSED
    got = licenses.label_documents(awkward_docs(spark, rows)).collect()
    have = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str)
    assert have == sorted(((i, *base(t)) for i, t in rows), key=str)
    labels = {r.doc_id: (r.labels, r.score) for r in got}
    assert labels[36][0] == "mit" and labels[36][1] >= 0.7        # words inserted: two diagonals, one span
    assert labels[37] == ("", 0.0) and labels[31] == ("", 0.0)
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) for r in got if r.base_labels)
    assert licenses.label_documents(awkward_docs(spark, [])).count() == 0


def test_license_places_on_the_small_table(spark):
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
           for r in licenses.op9_license_scan(spark, SMALL).collect()}
    assert got == {r.doc_id: base(r.text) for r in texts}


def statistics(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    again = {x for x in windows if windows.count(x) > 1} if len(windows) < 3000 else {
        x for x, n in __import__("collections").Counter(windows).items() if n > 1}
    repeat = {p for k, x in enumerate(windows) if x in again for p in (k, k + 1, k + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeat),
            n < 50 or 100 * len(repeat) > 50 * n)


def test_rule_statistics(spark):
    rows = awkward_texts() + [(40, "a b c a b c"), (41, "a b c d a b c\n\n \na b c d a b c\x0bx"), (42, "## <b>|&"),
                              (43, "one two one two one two"), (44, "a\u00a0b c\u2028d")]
    got = qr.judge(awkward_docs(spark, rows), []).collect()
    have = sorted(((r.doc_id, *(r[f"_q_{c}"] for c in qr.STATS[:5]), r._q_base_failed) for r in got), key=str)
    assert have == sorted(((i, *statistics(t)) for i, t in rows), key=str)
    assert all(r._q_kept == (not r._q_base_failed) for r in got)
    assert qr.judge(awkward_docs(spark, []), []).count() == 0


def test_rules_on_the_small_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    out = qr.op10_quality_rules(spark, SMALL)
    for r in out.collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == \
            statistics(texts[r.doc_id])
        assert not (r.kept and r.base_failed)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert out.filter("kept").count() <= out.filter(~F.col("base_failed")).count()


def test_learning_covers_and_prunes():
    import random
    rng = random.Random(2)
    rows = []
    for k in range(900):
        bad = k % 3 == 0
        a = rng.uniform(0.5, 1) if bad and k % 2 else rng.uniform(0, 0.4)
        b = rng.uniform(5, 9) if bad and not k % 2 else rng.uniform(0, 4)
        rows.append((a, b, rng.random(), 0 if bad else 1))
    rng.shuffle(rows)
    rules = qr.learn(rows)
    wrong = sum(any(qr._holds(r, x) for r in rules) == bool(x[-1]) for x in rows)
    assert 1 < len(rules) <= 4 and wrong <= 9 and all(len(r) <= 2 for r in rules)
    assert qr.learn([]) == [] and qr.learn([(1.0, 1)] * 10) == [] and qr.learn([(1.0, 0)] * 10) == []


def test_awkward_labels_and_stage(spark):
    docs = awkward_docs(spark)
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (999, 0)], "doc_id long, quality int")
    assert qr.fit(docs, labels) == [] and qr.fit(docs, labels.limit(0)) == []
    kept = qr.keep_good(docs, [])
    want = sorted(str(i) for i, t in awkward_texts() if not statistics(t)[-1])
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == want


def brute_labels(text, min_coverage=0.7, drift=3):
    """Labels and score by plain loops: hits by diagonal, neighbouring diagonals merged."""
    t = "".join(c.lower() if c.isascii() else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    labels, score = {label for k in range(len(w)) for p, label in licenses.PHRASES.items()
                     if w[k:k + len(p.split())] == p.split()}, 0.0
    score = 1.0 if labels else 0.0
    for body, label in licenses.NOTICES.items():
        b = body.split()
        votes = {}
        for p in range(len(w) - 1):
            for q in range(len(b) - 1):
                if w[p:p + 2] == b[q:q + 2]:
                    votes.setdefault(p - q, set()).add(q)
        groups = []
        for d in sorted(d for d, got in votes.items() if len(got) > 1):
            if groups and d - groups[-1][-1] <= drift:
                groups[-1].append(d)
            else:
                groups.append([d])
        for g in groups:
            share = len(set().union(*(votes[d] for d in g))) / (len(b) - 1)
            if share >= min_coverage:
                labels, score = labels | {label}, max(score, share)
    return ",".join(sorted(labels)), score


def test_labels_and_scores_equal_brute_force(spark):
    rows = LICENSED + [(40, " ".join(licenses.NOTICES)), (41, ("x " + next(iter(licenses.NOTICES)) + " y ") * 3)]
    rows += [(100 + r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()
             if len(r.text or "") < 3000]
    got = {r.doc_id: (r.labels, r.score) for r in licenses.label_documents(awkward_docs(spark, rows)).collect()}
    want = {i: brute_labels(t) for i, t in rows}
    assert {i: x[0] for i, x in got.items()} == {i: x[0] for i, x in want.items()}
    assert all(abs(got[i][1] - want[i][1]) < 1e-12 for i in want)


def test_the_native_queries_use_no_python_and_explode_once(spark):
    plan = licenses.op9_license_scan(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert plan.count("Generate posexplode") == 1
    rules = qr.op10_quality_rules(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in rules and "Arrow" not in rules and "Pandas" not in rules


def test_verdicts_equal_the_list_applied_by_hand(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    learnt = qr.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    # a list of several rules, in which the order matters
    by_hand = [[(0, ">", 300.0), (1, "<=", 1e9)], [(0, ">", 100.0)], [(1, ">", 0.2), (0, "<=", 60.0)]]
    for rules in (learnt, by_hand, []):
        names = list(qr.features())
        judged = qr.judge(docs, rules)
        rows = judged.select(*[c.alias(f"f_{k}") for k, c in qr.features().items()],
                             "_q_base_failed", "_q_rule", "_q_kept").collect()
        assert len(rows) == docs.count()
        for r in rows:
            value = [r[f"f_{k}"] for k in names]
            first = 0
            for number, rule in enumerate(rules, 1):
                if all(value[f] > v if op == ">" else value[f] <= v for f, op, v in rule):
                    first = number
                    break
            assert r._q_rule == first
            assert r._q_kept == (not r._q_base_failed and first == 0)
