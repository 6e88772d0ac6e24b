"""Entry point for spark-submit; see tallystone.plans.jobs."""

from tallystone.plans.jobs import main

if __name__ == "__main__":
    main()
