"""Make, move and summarise tables with Spark."""
