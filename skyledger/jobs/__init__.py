"""Command-line jobs: ``batch``, ``replay`` and ``stream``."""
