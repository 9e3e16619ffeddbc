"""Classification of short posts as Spark jobs: cleaning, tokens, sparse features, models."""
