"""End-to-end batch job and the checked-query registry."""
