"""Script for spark-submit: ``spark-submit --py-files meterline.zip run_job.py --out ...``."""

from meterline.plans.job import main

if __name__ == "__main__":
    main()
