"""Complete queries: enrichment of each dataset, and reports over the enriched tables."""
