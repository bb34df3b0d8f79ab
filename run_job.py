"""Entry point for spark-submit; see --help."""

from pagetally.cli import main

if __name__ == "__main__":
    main()
