"""Stand-ins for the indicator sources on the TPC-H-like test tables, and the registered queries."""
