"""The layers: bronze, silver and gold tables, their reports, and the jobs that write them."""
