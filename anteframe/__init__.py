"""Point-in-time feature tables on Spark: only what was known before an anchor time."""
