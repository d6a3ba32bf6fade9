"""Social-mention analytics as Spark jobs: landing, clean-up, daily totals, team detection."""
