"""Places of the test data, under a module name no other test folder uses."""

SF_SMALL = "/root/testdata/sf0.001"
