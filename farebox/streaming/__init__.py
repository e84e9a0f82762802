"""Incremental processing: partition-level incremental load with an audit
log (S-09..S-12) and the high-water-mark fact (S-13)."""
