"""Plans: the stages wired into whole queries, size checks, and the job."""
