"""Stream forms: the stateful fraud check and the pipeline that fans out to every sink."""
