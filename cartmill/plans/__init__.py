"""The marketplace job: staging, star schema, gold extracts, metrics, gated build."""
