"""Student-assessment analytics as Spark jobs: sources, scalar rules, joins, merges, reports and loads."""
