"""Sources and sinks: file readers (S1-S3, S5), the save step (S9, S10) and the test-data adapter."""
