"""DataFrame-to-DataFrame operators, parameterised by table and column names."""
