"""The registered queries: every operator on the driver's tables, and the same in plain SQL."""
