"""Folders of the shipped tables that the tests read."""

SF = {"0.001": "/root/testdata/sf0.001", "0.01": "/root/testdata/sf0.01"}
