"""Operations of a training-data pipeline, each on DataFrames of documents."""
