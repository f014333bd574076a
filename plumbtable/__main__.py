from plumbtable.cli import main

main()
