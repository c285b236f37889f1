"""Entry point for spark-submit; see `starloom/cli.py`."""

from starloom.cli import main

if __name__ == "__main__":
    main()
