"""Where the given tables lie; a module of its own, as each test folder has its own conftest."""

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
