"""Jobs: the operators composed into the layers of the pipeline."""
