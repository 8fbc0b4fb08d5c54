"""Column-level helpers: wire conversions, money, periods, digests."""
