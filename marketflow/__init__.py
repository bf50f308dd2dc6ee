"""marketflow: market, web-log and cell-table analytics as DataFrame functions."""
