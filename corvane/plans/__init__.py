"""Ready-made analyses over posts, trips, staff and movies."""
