"""Training, run tracking, selection and batch scoring on Spark ML."""
