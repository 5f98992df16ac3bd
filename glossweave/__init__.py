"""glossweave: translation-fact analytics and corpus preparation as Spark jobs."""
