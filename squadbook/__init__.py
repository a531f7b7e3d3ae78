"""Season rosters, rankings and mention counts as Spark DataFrame plans."""
