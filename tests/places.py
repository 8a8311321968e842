"""Where the tests find the repository and its tables."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF001 = "/root/testdata/sf0.001"
SF01 = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
