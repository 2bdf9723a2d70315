"""Plans: star schema, data marts, ad-hoc queries, layers and the pipeline."""
