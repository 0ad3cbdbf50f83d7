"""Shop-behaviour analytics, recommendation and notification jobs for Spark."""
