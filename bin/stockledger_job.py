"""spark-submit launcher: ``spark-submit --py-files stockledger.zip bin/stockledger_job.py --help``."""

from stockledger.__main__ import main

if __name__ == "__main__":
    main()
