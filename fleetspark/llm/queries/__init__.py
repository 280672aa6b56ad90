"""One thin query per operator."""
