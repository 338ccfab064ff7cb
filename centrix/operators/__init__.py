"""DataFrame operators: assignment, update, cost, scoring, seeding, expansion,
projections, run history and reports."""
