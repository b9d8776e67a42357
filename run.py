"""Entry script for spark-submit: spark-submit --py-files dispatchlens.zip run.py COMMAND ..."""

from dispatchlens.__main__ import main

if __name__ == "__main__":
    main()
