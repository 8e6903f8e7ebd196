"""spark-submit entry point; see profila/__main__.py."""

from profila.__main__ import main

if __name__ == "__main__":
    main()
