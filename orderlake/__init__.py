"""orderlake: order analytics as plain PySpark DataFrame functions."""
