"""Entry point for spark-submit; see curfew/plans/daily_job.py."""

from curfew.plans.daily_job import main

if __name__ == "__main__":
    raise SystemExit(main())
