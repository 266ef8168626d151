"""What both streams ask of the file source."""

# The source passes over files that are a week older than the newest one it has seen,
# such as a late copy that kept its date. This age is beyond any date a file can have, so
# none is ever passed over; the price is that the source remembers all file names.
MAX_FILE_AGE = "100000000d"
