"""What a user calls: standardise, load, build features, report."""
