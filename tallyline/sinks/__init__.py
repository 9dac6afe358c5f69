"""Writers: the only code that runs jobs."""
