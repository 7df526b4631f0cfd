"""Query catalogue (driver contract) and composed pipelines."""
