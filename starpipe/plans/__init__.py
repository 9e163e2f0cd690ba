"""The pipeline's products: cleaned tables, the star schema, KPIs, registry."""
