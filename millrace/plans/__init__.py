"""Table commits, exports, SQL, events and jobs."""
