from cinder.jobs import main

main()
