"""Multi-step jobs: the layered run, its receipts and its reports."""
