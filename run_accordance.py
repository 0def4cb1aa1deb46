"""The script for spark-submit: ``spark-submit ... run_accordance.py hive jobs [job_name]``."""

from accordance.__main__ import exit_code, main

if __name__ == "__main__":
    raise SystemExit(exit_code(main()))
