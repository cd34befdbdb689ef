"""Operators: DataFrame-in, DataFrame-out building blocks.

stats (counts, means, dedup, top-n), similarity (co-rating sums, top-k),
candidates (pool per user), features / encoding (feature table, one-hot),
model and boosting (boosted trees), scoring (scorers, pair scoring), evaluate, reports,
recommend.
"""
