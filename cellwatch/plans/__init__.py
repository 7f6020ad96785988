"""Plans: the composed pipelines (fleet extract, silent report, chain, train/score, jobs)."""
