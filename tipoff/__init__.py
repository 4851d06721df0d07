"""tipoff: a basketball analytics warehouse as Spark jobs."""
