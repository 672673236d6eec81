"""Where data enters and leaves: archives, landing files, tables."""
