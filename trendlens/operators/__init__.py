"""DataFrame operators: sketches, samples, exact baseline, metrics, export, synthesis."""
