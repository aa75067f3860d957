"""Plans: model fitting and scoring jobs, tuning, the end-to-end house-price
flows, and the catalog of registered queries with their SQL oracles."""
