"""The driver's tables seen as claims tables, the registered queries, their SQL."""
