"""granary: sequencing-style analytics as plain functions from DataFrame to DataFrame."""
