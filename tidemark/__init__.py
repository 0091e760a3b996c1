"""Keep an analytical star schema current from an edited change feed, and prove it complete, with Spark plans."""
