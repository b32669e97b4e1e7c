"""Paths shared by the tests."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("KEYFLOW_ORACLE_SF", SF_SMALL)
