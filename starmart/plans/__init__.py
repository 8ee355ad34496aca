"""Star build, marts, the driver-table analogue and the query registry."""
