"""Set-based Spark jobs over rental-shop, museum and transit tables."""
