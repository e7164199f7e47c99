"""Operations of a training-data pipeline on a table of documents."""
