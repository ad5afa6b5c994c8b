"""tripmill: ride-share ELT and feature marts, written as Spark DataFrame jobs."""
