"""Operations of a training-data pipeline.  Nothing else in the library
imports this subpackage; ``registry`` holds its queries and SQL."""
