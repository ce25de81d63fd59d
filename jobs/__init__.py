"""Jobs that run from the command line: `python -m jobs.<name> --help`. Each keeps its work in a function that takes a session."""
