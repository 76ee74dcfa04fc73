"""Quality rules as learned decision lists, in DataFrame expressions only.

Statistics of every whole text are Spark column expressions. Sequential
covering learns an ordered list of threshold conjunctions that mark bad
documents from a bounded sample of labelled statistics: each rule is grown
condition by condition on one part of the sample and pruned on the other.
The list is then emitted as one Spark conditional expression.

Null or empty texts have no words and fail the base rule; null labels are not
learned from; without labels (or without bad ones) the list is empty and only
the base rule counts. Repeated rows are judged alike. Other columns are kept
and never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
         "n_upper", "n_marks", "n_lines")
FEATURES = ("symbols_per_word", "mark_share", "upper_share", "dup_line_share", "repeat_share",
            "word_length", "words_per_line")
SAMPLE_PER_CLASS = 4000        # bound on the labelled documents used for fitting
MIN_WORDS = 50


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the columns of STATS, prefixed ``_q_``; one pass, no shuffle."""
    t = F.coalesce(F.col(text), F.lit(""))
    d = docs.withColumn("_q_words", F.filter(F.split(t, SPACES), lambda w: w != ""))
    d = d.withColumn("_q_n_words", F.size("_q_words").cast("long"))
    # transform(array(x), y -> f(y))[0] binds x once, also where the optimizer
    # moves these expressions into a filter: x[i] stays a lookup.
    # 32 bits of each window's hash above its position, sorted as plain numbers:
    # equal hashes are neighbours. Only such windows are compared as strings.
    d = d.withColumn("_q_packed", F.expr(
        "sort_array(transform(array(_q_words), w -> transform(if(size(w) < 3, array(), "
        "sequence(0, size(w) - 3)), i -> shiftleft(xxhash64(w[i], w[i + 1], w[i + 2]), 32) + i))[0])"))
    d = d.withColumn("_q_alike", F.expr(
        "transform(array(_q_packed), z -> transform(filter(z, (p, k) -> "
        "(k > 0 and shiftright(z[k - 1], 32) = shiftright(p, 32)) or "
        "(k + 1 < size(z) and shiftright(z[k + 1], 32) = shiftright(p, 32))), "
        "p -> int(p & 4294967295)))[0]"))
    d = d.withColumn("_q_sorted", F.expr(
        "transform(array(_q_words), w -> sort_array(transform(_q_alike, i -> "
        "struct(concat_ws(' ', w[i], w[i + 1], w[i + 2]) as g, i as at))))[0]"))
    d = d.withColumn("_q_again", F.expr(
        "transform(array(_q_sorted), z -> transform(filter(z, (s, k) -> (k > 0 and z[k - 1].g = s.g) "
        "or (k + 1 < size(z) and z[k + 1].g = s.g)), s -> s.at))[0]"))
    repeated = F.size(F.array_distinct(F.concat(
        "_q_again", F.transform("_q_again", lambda p: p + 1),
        F.transform("_q_again", lambda p: p + 2))))
    d = d.withColumn("_q_lines", F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))

    def only(kept: str) -> Column:
        return F.length(F.regexp_replace(t, f"[^{kept}]+", "")).cast("long")

    return d.withColumns({
        "_q_word_chars": F.length(F.regexp_replace(t, SPACES, "")).cast("long"),
        "_q_n_symbols": only(SYMBOLS),
        "_q_n_dup_lines": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"),
        "_q_n_repeat_words": repeated.cast("long"),
        "_q_n_upper": only("A-Z"),
        "_q_n_marks": only("!?"),
        "_q_n_lines": F.size("_q_lines").cast("long"),
    }).drop("_q_words", "_q_packed", "_q_alike", "_q_sorted", "_q_again", "_q_lines")


def features() -> dict[str, Column]:
    """Ratios of the statistics; 0 where the denominator is 0."""
    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(f"_q_{a}").cast("double"), F.col(f"_q_{b}").cast("double")),
                          F.lit(0.0))
    return {"symbols_per_word": share("n_symbols", "n_words"),
            "mark_share": share("n_marks", "word_chars"),
            "upper_share": share("n_upper", "word_chars"),
            "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "word_length": share("word_chars", "n_words"),
            "words_per_line": share("n_words", "n_lines")}


def base_failed() -> Column:
    return ((F.col("_q_n_words") < MIN_WORDS)
            | (100 * F.col("_q_n_repeat_words") > 50 * F.col("_q_n_words")))


def filtered(d: DataFrame, cond: Column) -> DataFrame:
    """The rows for which ``cond`` holds. The row id keeps the optimizer from moving
    the filter below the statistics, which would compute them once for each use."""
    return (d.withColumn("_q_row", F.monotonically_increasing_id())
            .filter(cond & (F.col("_q_row") >= 0)).drop("_q_row"))


# -- learning -------------------------------------------------------------------------------

def _holds(rule: list[tuple], row: tuple) -> bool:
    return all((row[f] > v) if op == ">" else (row[f] <= v) for f, op, v in rule)


def _counts(rule: list[tuple], rows: list[tuple]) -> tuple[int, int]:
    """(bad, good) rows that the rule covers; the label is the last field, 1 = good."""
    bad = good = 0
    for r in rows:
        if _holds(rule, r):
            good += r[-1]
            bad += 1 - r[-1]
    return bad, good


def _best_condition(rows: list[tuple], n_features: int) -> tuple | None:
    """The threshold with the largest information gain for the bad class."""
    import math
    bad_all = sum(1 - r[-1] for r in rows)
    if not bad_all or bad_all == len(rows):
        return None
    base, best, best_gain = math.log2(bad_all / len(rows)), None, 1e-9
    for f in range(n_features):
        ordered = sorted((r[f], 1 - r[-1]) for r in rows)
        bad = 0
        for k in range(len(ordered) - 1):
            bad += ordered[k][1]
            low, high = ordered[k][0], ordered[k + 1][0]
            if low == high:
                continue
            cut = (low + high) / 2
            for op, p, n in (("<=", bad, k + 1), (">", bad_all - bad, len(ordered) - k - 1)):
                gain = p * (math.log2(p / n) - base) if p else 0
                if gain > best_gain:
                    best, best_gain = (f, op, cut), gain
    return best


def learn(rows: list[tuple], max_rules: int = 12, max_conditions: int = 4,
          min_covered: int = 5, min_precision: float = 0.97) -> list[list[tuple]]:
    """Ordered rules for the bad class from (features..., label) rows.

    Every third row prunes, the others grow. A rule is kept if it covers
    enough bad rows and hardly any good ones in both parts together.
    """
    rules: list[list[tuple]] = []
    grow = [r for k, r in enumerate(rows) if k % 3 != 2]
    prune = [r for k, r in enumerate(rows) if k % 3 == 2]
    n_features = len(rows[0]) - 1 if rows else 0
    while len(rules) < max_rules and any(not r[-1] for r in grow):
        rule: list[tuple] = []
        covered = grow
        while len(rule) < max_conditions and any(r[-1] for r in covered):
            cond = _best_condition(covered, n_features)
            if cond is None:
                break
            rule.append(cond)
            covered = [r for r in covered if _holds([cond], r)]
        if not rule:
            break

        def worth(k: int) -> float:
            bad, good = _counts(rule[:k], prune)
            return (bad - good) / max(1, bad + good)
        # the shortest prefix that does as well on the pruning rows
        rule = rule[:max(range(1, len(rule) + 1), key=lambda k: (worth(k), -k))]
        bad, good = (a + b for a, b in zip(_counts(rule, grow), _counts(rule, prune)))
        if bad < min_covered or bad < min_precision * (bad + good):
            break
        rules.append(rule)
        grow = [r for r in grow if not _holds(rule, r)]
        prune = [r for r in prune if not _holds(rule, r)]
    return rules


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality",
        per_class: int = SAMPLE_PER_CLASS) -> list[list[tuple]]:
    """Learn the list from at most ``per_class`` labelled documents of each class."""
    rows = labels.select("doc_id", F.col(target).cast("int").alias("_q_label")).dropna()
    chosen = None
    for value in (0, 1):
        some = (rows.filter(F.col("_q_label") == value).dropDuplicates(["doc_id"])
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class))
        chosen = some if chosen is None else chosen.unionByName(some)
    # bounded by per_class, so the broadcast and the collected rows are, too
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = filtered(with_statistics(sample), ~base_failed())
    got = (sample.select(F.xxhash64("doc_id").alias("_q_at"), *[c.alias(k) for k, c in features().items()],
                         "_q_label").limit(4 * per_class).collect())
    return learn([tuple(r)[1:] for r in sorted(got)])


def rejected(rules: list[list[tuple]]) -> Column:
    """The list as an ordered conditional: the number of the first rule that
    holds (from 1), 0 if none does."""
    f = list(features().values())
    out = None
    for k, rule in enumerate(rules, 1):
        cond = F.lit(True)
        for i, op, v in rule:
            cond = cond & ((f[i] > v) if op == ">" else (f[i] <= v))
        out = F.when(cond, k) if out is None else out.when(cond, k)
    return F.lit(0) if out is None else out.otherwise(0)


def judge(docs: DataFrame, rules: list[list[tuple]]) -> DataFrame:
    """``docs`` with the statistics (``_q_*``), ``_q_base_failed``, ``_q_rule``
    and ``_q_kept``."""
    d = with_statistics(docs)
    return d.withColumns({"_q_base_failed": base_failed(), "_q_rule": rejected(rules)}).withColumn(
        "_q_kept", ~F.col("_q_base_failed") & (F.col("_q_rule") == 0))


def keep_good(docs: DataFrame, rules: list[list[tuple]]) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    return filtered(judge(docs, rules), F.col("_q_kept")).select(*docs.columns)


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Word statistics and verdict of every document."""
    from .frames import table
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = fit(docs, table(spark, sf_dir, "labels"))
    out = judge(docs, rules)
    return out.select("doc_id", *[F.col(f"_q_{c}").alias(c) for c in STATS[:5]],
                      F.col("_q_base_failed").alias("base_failed"), F.col("_q_kept").alias("kept"),
                      F.col("_q_rule").cast("int").alias("rule"))
