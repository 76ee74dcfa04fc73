"""Plans: rule sets and the load pipelines built from the operators."""
