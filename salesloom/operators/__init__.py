"""Table-level operators, DataFrame in and DataFrame out."""
