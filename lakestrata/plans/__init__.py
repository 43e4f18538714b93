"""Plans: the lake's steps and whole run, its checks, and the operator
catalogue on the test tables with its SQL oracle."""
