"""Group-insurance warehouse jobs on Spark: lazy DataFrame operators with an explicit as-of date."""
