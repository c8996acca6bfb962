"""Domain staging pipelines, the end-to-end delta load, and the registered query set."""
