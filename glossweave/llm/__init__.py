"""Ten operators that prepare a training corpus, each a Spark job over whole tables."""
