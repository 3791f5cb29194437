"""The stages of the pipeline, each from stored input to stored output."""
