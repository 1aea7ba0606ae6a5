"""Table operators: validation, latest-wins, SCD2, neighbours, point-in-time binding, marts, reconciliation."""
