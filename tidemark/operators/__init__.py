"""Operators: every public function takes and returns DataFrames."""
