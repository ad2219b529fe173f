"""Card-fraud warehouse as Spark jobs: load daily drops, keep dimensions, report fraud."""
