"""DataFrame -> DataFrame operators (detection, merge, review, redaction, jobs, protection)."""
