"""Query plans over the benchmark tables: dataset specs (role mapping),
bronze-shaped derivations, one builder per operator, and their SQL oracles."""
