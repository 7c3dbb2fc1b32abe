from tradeflow.cli import main

main()
