"""DataFrame-to-DataFrame steps. None of them triggers a job."""
