"""voxloom: curation of speech datasets as Spark plans."""
