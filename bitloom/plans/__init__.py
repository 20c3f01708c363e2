"""Plans: what to fetch, and the stages from pages to published tables."""
