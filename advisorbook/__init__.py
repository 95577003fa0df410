"""Monthly advisor and portfolio KPIs from cumulative snapshot files, on Spark."""
