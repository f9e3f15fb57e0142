"""spark-submit entry point for the batch and streaming jobs.

    spark-submit --py-files pickwise.zip scripts/run_job.py itemcf --base hdfs:///data/reco
"""

import sys

from pickwise.plans.jobs import main

if __name__ == "__main__":
    main(sys.argv[1:])
