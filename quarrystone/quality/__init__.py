"""Data contracts: declarations, checks, the suite that runs them and the gate that acts on it."""
