"""vacancia: listings in, clean de-duplicated contact-enriched tables out, as Spark DataFrame jobs."""
