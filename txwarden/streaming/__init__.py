"""Features kept up to date as transactions arrive."""
