"""Jobs and queries: warehouse load, checks, KPIs, dashboards, lake queries, models."""
