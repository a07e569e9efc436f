"""The repeated batch jobs as streams over landing folders."""
