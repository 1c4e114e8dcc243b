"""Models and jobs: silver, gold, reports, check suite, refresh, cleanup, registry."""
