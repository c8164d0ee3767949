"""The medallion jobs, from topics to notifications."""
