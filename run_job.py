"""spark-submit entry: ``spark-submit --py-files delaycast.zip run_job.py <job> ...``"""

from delaycast.__main__ import main

if __name__ == "__main__":
    main()
