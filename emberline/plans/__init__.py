"""Query plans: registered queries, their SQL twins, serving queries, batch job."""
