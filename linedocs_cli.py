"""spark-submit entry: ``spark-submit --py-files linedocs.zip linedocs_cli.py index ...``."""

from linedocs.__main__ import main

if __name__ == "__main__":
    raise SystemExit(main())
