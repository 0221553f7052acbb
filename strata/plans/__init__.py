"""Config-driven plans: column mappings, control tables, and the layer jobs."""
