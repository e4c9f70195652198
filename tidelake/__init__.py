"""tidelake: an image lake and auto-labelling engine made of Spark jobs."""
