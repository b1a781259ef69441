"""Chains of operators over the driver's test tables, the query catalogue,
and the SQL twins used as an oracle."""
