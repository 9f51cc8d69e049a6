"""Single steps: DataFrames in, one lazy DataFrame out."""
