"""Table operators: DataFrame in, DataFrame out. Only ``snapshot`` touches storage."""
