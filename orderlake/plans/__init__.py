"""One module per subject; every public function maps DataFrames to a DataFrame."""
