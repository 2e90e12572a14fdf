"""The library run over the supplied star-schema tables, with independent SQL for each query."""
