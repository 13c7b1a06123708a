"""quirework: page-image analytics and corpus preparation on Spark."""
