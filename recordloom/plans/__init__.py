"""Whole plans: views, registered queries with their SQL, and the entry points."""
