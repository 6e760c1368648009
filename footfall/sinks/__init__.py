"""Writers and the merge rules of result tables."""
