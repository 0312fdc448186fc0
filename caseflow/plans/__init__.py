"""Table definitions from the landing zone to the marts and reports, and the refresh driver."""
