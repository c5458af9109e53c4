"""Layer plans: silver and gold of both models, and the pipeline runner."""
